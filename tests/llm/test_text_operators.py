"""The text operators against brute force on small tables, with the cases
every one of them has to stand: nulls in any column, empty and long texts,
ties, repeated rows, clashing column names, an empty table."""

from __future__ import annotations

import hashlib
import json
import random
import re
import zlib
from array import array
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from nimbus.llm import (bpe, bytes_dedup, components, decontaminate, exact_dedup, jaccard_join, lang_id,
                        licenses, passages, phrase_dedup, token_file, toxicity)
from nimbus.llm.common import staged_folders
from nimbus.llm.queries import ORACLE_SQL, QUERIES
from nimbus.session import work_dir

SF = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
# Input columns named like columns the operators use inside.
CLASHES = ["did", "rk", "uid", "kept", "score", "spans", "key", "id", "region", "anchor", "digest", "n_tokens", "__did", "part"]
SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s or "")


def prose(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def corpus() -> list[tuple]:
    """(doc_id, text): families of copies, shared passages, odd texts."""
    rng = random.Random(11)
    base = [prose(rng, 60) for _ in range(6)]
    passage = prose(rng, 70, 5000)
    rows = []
    for i, b in enumerate(base):
        rows.append(b)
        w = b.split()
        for k in range(3):
            v = list(w)
            v[(7 * k + i) % len(v)] = f"x{k}"
            rows.append(" ".join(v))
    rows += [base[0], base[0].replace(" ", "  \n", 3), f"{prose(rng, 25)} {passage} {prose(rng, 30)}", f"{passage}\t{prose(rng, 10)}", f"{prose(rng, 5)} {passage}"]
    rows += ["", None, " \n\t ", "one", "One", "a b c", "A B c", "é ß Σ İ 漢字 👍", "<|endoftext|> text<|startoftext|>", "a " * 60, "ab" * 300, "ab" * 300]
    rows += [("la le lu " * 4000).strip(), f"{prose(rng, 3000, 50)} {passage}", "\x00\x01", "x" * 5000]
    out = [(i * 3 % 101, t) for i, t in enumerate(rows)]
    out += [(None, f"only {passage}"), out[0], out[2]]   # no id; repeated rows
    rng.shuffle(out)
    return out


def table(spark, rows, extra=CLASHES):
    df = spark.createDataFrame([(i, t, None if (i or 0) % 5 == 0 else "en", None, None) for i, t in rows],
                               "doc_id long, text string, lang string, source string, n_chars long")
    return df.repartition(3).withColumns({c: F.lit("clash") for c in extra})


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return table(spark, rows).cache()


@pytest.fixture(scope="module")
def none(spark):
    return table(spark, [(1, "x")]).where("false")


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


# ---------------------------------------------------------------- 1 and 8

def test_bpe_equals_the_library(spark, rows, docs, none):
    lib = Tokenizer.from_file(TOKENIZER)
    want = []
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(array("I", ids).tobytes()), sha(lib.decode(ids, skip_special_tokens=False))))
    run = lambda d: bpe.digests(bpe.decode_documents(bpe.encode_documents(d, TOKENIZER), TOKENIZER))
    assert got(run(docs)) == sorted(want, key=repr)
    assert got(run(none)) == []


def test_bpe_on_odd_letters():
    lib, own, chunks = Tokenizer.from_file(TOKENIZER), bpe.load(TOKENIZER), token_file.load(TOKENIZER)
    rng = random.Random(4)
    letters = "abTI'stre ΣσİÉ́̈  \n<|startoftext|>endoftext1９ß가𝒳👍\x1c\x85　\x00"
    for _ in range(2000):
        s = "".join(rng.choice(letters) for _ in range(rng.randint(0, 25)))
        s += "<|endoftext|>" + s[::-1] if rng.random() < 0.3 else ""
        ids = lib.encode(s, add_special_tokens=False).ids
        assert own.encode(s) == ids == array(chunks.code, chunks.encode_bytes(s.encode())).tolist(), s
        assert own.decode(ids) == lib.decode(ids, skip_special_tokens=False)


def test_merges_skip_stale_entries():
    ranks = {(1, 1): (0, 2), (2, 1): (1, 3), (2, 2): (2, 4)}
    assert bpe.merge_symbols([1] * 5, ranks) == [2, 3] and bpe.merge_symbols([1], ranks) == [1]
    assert bpe.merge_symbols([1] * 4, ranks) == [4]


def test_token_files(spark, rows, docs, none):
    lib = Tokenizer.from_file(TOKENIZER)
    folder = work_dir(spark, "tokens")
    manifest = token_file.write_token_files(docs, TOKENIZER, folder, partitions=3)
    found = {}
    for r in token_file.read_token_files(manifest, folder).collect():
        found.setdefault(r.doc_id, []).append((r.start, r.n_tokens, r.ids_crc32))
    at = 0
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0]))
    for i, group in ((i, [t for j, t in order if j == i]) for i in dict.fromkeys(j for j, _ in order)):
        places = sorted(found[i])
        ids = [lib.encode(t or "", add_special_tokens=False).ids + [1] for t in group]
        assert sorted((len(x), zlib.crc32(array("I", x).tobytes())) for x in ids) == sorted(p[1:] for p in places)
        for start, n, _ in places:
            assert start == at
            at += n
    # Random access without the manifest: every sequence has the same length, the mask marks the padding.
    parts = sorted({(r.part, r.file) for r in manifest.collect()})
    real = 0
    for _, name in parts:
        reader = token_file.SequenceReader(folder, name)
        for k in range(reader.file.num_record_batches):
            b = reader.batch(k)
            assert b.schema.field("input_ids").type.list_size == token_file.SEQUENCE
            real += int(np.sum(b.column(1).flatten().to_numpy(zero_copy_only=False)))
    assert real == at
    assert got(token_file.token_files(none, TOKENIZER)) == []


# ---------------------------------------------------------------- 2 and 9

def phrase_brute(rows):
    first, words = {}, {}
    for i, t in rows:
        words[(i, t)] = SPACE.findall(t or "")
    order = sorted(words, key=lambda k: (k[0] is not None, k[0] or 0))
    for key in order:
        w = words[key]
        for a in range(len(w) - 19):
            first.setdefault(tuple(w[a:a + 20]), (key, a))
    out = []
    for i, t in rows:
        w = words[(i, t)]
        gone = set()
        for a in range(len(w) - 19):
            if first[tuple(w[a:a + 20])] != ((i, t), a):
                gone.update(range(a, a + 20))
        out.append((i, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return sorted(out, key=repr)


def bytes_brute(rows, size=200):
    seen, raw = defaultdict(set), {}
    for i, t in rows:
        raw[(i, t)] = (t or "").encode()
    for key, r in raw.items():
        for a in range(len(r) - size + 1):
            seen[r[a:a + size]].add((key, a))
    out = []
    for i, t in rows:
        r = raw[(i, t)]
        cover = np.zeros(len(r) + 1, int)
        for a in range(len(r) - size + 1):
            if len(seen[r[a:a + size]]) > 1:
                cover[a] += 1
                cover[a + size] -= 1
        gone = np.cumsum(cover)[:-1] > 0
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i, len(r), int(gone.sum()), spans, sha(bytes(np.frombuffer(r, np.uint8)[~gone]))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot", [None, 2])
def test_phrase_dedup(rows, docs, hot):
    assert got(phrase_dedup.report(docs, hot)) == phrase_brute(rows)


@pytest.mark.parametrize("hot", [None, 2])
def test_bytes_dedup(rows, docs, hot):
    assert got(bytes_dedup.report(docs, hot)) == bytes_brute(rows)


def test_passages_of_documents_that_share_an_id(spark):
    rng = random.Random(5)
    passage, other = prose(rng, 60, 5000), prose(rng, 60, 5000)
    rows = [(None, f"{passage} a{k}") for k in range(3)] + [(7, f"{other} b0"), (7, f"{other} b1"), (8, prose(rng, 40, 5000))]
    rows += [rows[0], rows[3]]  # repeated rows are one document
    docs = table(spark, rows)
    for hot in (None, 2):
        words = [r for r in phrase_dedup.report(docs, hot).collect()]
        assert sorted((r.doc_id or 0, r.n_removed) for r in words if r.doc_id != 8) in (
            sorted([(0, 0)] * a + [(0, 60)] * (4 - a) + [(7, 0)] * b + [(7, 60)] * (3 - b)) for a in (1, 2) for b in (1, 2))
        assert sorted((r.doc_id or 0, r.n_removed >= 200) for r in bytes_dedup.report(docs, hot).collect()) == [(0, True)] * 4 + [(7, True)] * 3 + [(8, False)]


def test_passages_of_an_empty_table(none):
    assert got(phrase_dedup.report(none)) == [] and got(bytes_dedup.report(none)) == []


@pytest.mark.parametrize("op, brute, at_once", [(phrase_dedup, phrase_brute, 1.25), (bytes_dedup, bytes_brute, 0.6)])
def test_passages_of_hot_lines_and_copies_stay_small(spark, monkeypatch, op, brute, at_once):
    rng = random.Random(8)
    line = prose(rng, 25, 9000)
    rows = [(i, f"{prose(rng, 60, 9000)} {line} {prose(rng, 60, 9000)}") for i in range(60)]
    rows += [(1000 + i, t) for i, t in rows]   # every text twice: everything recurs
    docs, size = table(spark, rows), sum(len(t) for _, t in rows)
    took, staged, before = defaultdict(list), passages.staged, set(staged_folders(spark))

    def watched(df, name, *made):
        out = staged(df, name, *made)
        if "seg" in out.columns:
            took[name].append(out.agg(F.sum(F.octet_length("seg"))).first()[0] or 0)
        return out

    monkeypatch.setattr(passages, "AT_ONCE", at_once, raising=False)
    monkeypatch.setattr(passages, "staged", watched)
    assert got(op.report(docs, 20)) == brute(rows)
    # Segments by rounds, and no table with a row for each window around the line.
    assert max(took["segments"]) <= (at_once + 0.3) * size
    assert max(sum(took[n]) for n in took if "segments" not in n) <= 2 * size
    assert len(set(staged_folders(spark)) - before) == 1   # the spans


def test_anchors_grow_to_the_window():
    for scheme in (phrase_dedup.WORDS, bytes_dedup.BYTES):
        k, steps = scheme.k, 0
        while k < scheme.window:
            assert k < (k := scheme.longer(k)) <= scheme.window
            steps += 1
        assert steps <= 4


def test_corpus_order_is_suffix_order():
    rng = random.Random(3)
    for _ in range(40):
        size = rng.choice([3, 8, 20])
        segs = [bytes(rng.choice(b"aaabbbcde") for _ in range(rng.randint(1, 80))) for _ in range(rng.randint(1, 8))]
        segs += [segs[0][5:] + segs[-1], segs[0] * 3]
        segs = [s for s in segs if s]
        order, owner, offset = bytes_dedup.corpus_order(segs, size)
        raw = b"".join(segs)
        assert [raw[x:x + size] for x in order] == sorted(s[j:j + size] for s in segs for j in range(len(s) - size + 1))
        assert sorted(zip(owner.tolist(), offset.tolist())) == [(i, j) for i, s in enumerate(segs) for j in range(len(s) - size + 1)]


def test_runs_cover_every_window_once(monkeypatch):
    monkeypatch.setattr(passages, "SLICE", 97)
    texts = [t.encode() for _, t in corpus() if t]
    for scheme in (phrase_dedup.WORDS, passages.Scheme("byte", 200, 32, 64)):
        units = scheme.units(texts)
        _, doc, begin, n = passages.runs(units, scheme)
        seen = [(d, b - units.first[d] + k) for d, b, m in zip(doc.tolist(), begin.tolist(), n.tolist()) for k in range(m)]
        size = np.diff(units.first)
        assert sorted(seen) == [(d, k) for d in range(len(texts)) for k in range(size[d] - scheme.window + 1)]
        assert n.max() <= scheme.longest_run


# ---------------------------------------------------------------- 3 and 4

def labelled(spark):
    rng = random.Random(2)
    insults, groups = ["zbad", "zvile", "zscum"], ["folka", "folkb"]
    docs, labels = [], []
    for i in range(900):
        words = [f"{chr(97 + k // 30)}{chr(97 + k % 26)}{chr(97 + k % 23)}om" for k in (rng.randrange(700) for _ in range(40))]
        bad = i % 4 == 0
        if bad:
            words[rng.randrange(40)] = rng.choice(insults)
            words[rng.randrange(40)] = rng.choice(groups)
        docs.append((i, " ".join(words)))
        labels.append((i, None, int(bad)))
    docs += [(2000, None), (2001, ""), (None, "zbad folka")]
    labels += [(3000, 1, 1), (4, None, None), (None, 1, 1), labels[0]]
    return (table(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("text", F.lit("clash")), {d: y for d, _, y in labels if d is not None and d < 900})


def test_toxicity_learns_and_holds_out(spark, none):
    docs, labels, truth = labelled(spark)
    out = toxicity.predictions(toxicity.score(docs, toxicity.fit(docs, labels, min_z=4.0))).collect()
    assert len(out) == 903
    for r in out:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [r for r in out if r.held_out and r.doc_id < 900]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(r.predicted == 0 for r in out if r.doc_id in (2000, 2001))
    empty = toxicity.fit(docs, labels.where("false"))
    assert {r.score for r in toxicity.score(docs, empty).collect()} == {toxicity.score(docs, empty).first().score}
    assert got(toxicity.score(none, empty)) == []


def test_toxicity_of_pairs_and_of_few_rows(spark):
    """With the production defaults: two words that are toxic only together
    (each alone is as toxic as any), and an insult of a few rows."""
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(2400):
        words = {f"{chr(97 + k // 30)}{chr(97 + k % 26)}{chr(97 + k % 23)}om" for k in (rng.randrange(700) for _ in range(25))}
        both, rare = i % 8 == 0, i % 150 == 7
        words |= {"dull", "folka"} if both else {"dull"} if i % 8 in (1, 2, 3) else {"folka"} if i % 8 in (4, 5, 6) else set()
        # One in four with either word and without: neither tells anything alone.
        bad = both or rare or (i % 8 == 7 and rng.random() < 0.25)
        words |= {"zrare"} if rare else {"zother"} if bad and not both else set()
        docs.append((i, " ".join(sorted(words))))
        labels.append((i, None, int(bad)))
    docs = table(spark, docs)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    term = lambda w: toxicity.word_terms(w)[0]
    assert {term("dull"), term("folka"), term("zrare")} <= set(model.at)
    held = [r for r in toxicity.predictions(toxicity.score(docs, model)).collect() if r.held_out]
    truth = {i: y for i, _, y in labels}
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def pairs_brute(rows, labels, p):
    """Every pair of words in every row."""
    import math
    n, pos = Counter(), Counter()
    for r, y in zip(rows, labels, strict=True):
        for k in (*((t,) for t in r), *((a, b) for a in r for b in r if a < b)):
            n[k] += 1
            pos[k] += y
    words = [k[0] for k in n if len(k) == 1 and n[k] >= 5]
    least, rate = math.log(max(2, len(words) * (len(words) - 1) / 2)), {w: max(p, pos[(w,)] / n[(w,)]) for w in words}
    out = {}
    for (a, b) in (k for k in n if len(k) == 2 and n[k] >= 5 and k[0] in rate and k[1] in rate):
        base, q = max(rate[a], rate[b]), pos[(a, b)] / n[(a, b)]
        if q > base:
            z = n[(a, b)] * (q * math.log(q / base) + ((1 - q) * math.log((1 - q) / (1 - base)) if q < 1 else 0))
            if z >= least:
                out[a, b] = z
    return out


def test_words_neutral_alone_enter_as_a_pair():
    rng = random.Random(6)
    rows = [sorted({rng.randrange(2, 40) for _ in range(8)} | {0: {0, 1}, 1: {0}, 2: {1}, 3: set()}[i % 4]) for i in range(800)]
    labels = [int(i % 4 in (0, 3)) for i in range(800)]   # together or neither: each alone is at the mean rate
    for y, p in ((labels, 0.5), ([rng.randrange(2) for _ in rows], 0.5), ([int(0 in r and 5 in r or rng.random() < 0.1) for r in rows], 0.2)):
        want = pairs_brute(rows, y, p)
        assert set(toxicity.pairs(rows, y, list(range(40)), p)) == {w for pair in want for w in pair}
        if y is labels:
            assert set(want) == {(0, 1)}
    assert toxicity.pairs([], [], [], 0.5) == []


def test_score_is_the_sum_over_all_pairs(spark):
    import math
    rng = np.random.default_rng(3)
    words = [f"w{chr(97 + i)}x" for i in range(12)]
    terms = sorted({t for w in words for t in toxicity.word_terms(w)})
    fm = toxicity.FactorizationMachine(terms, -0.3, rng.normal(0, 0.4, len(terms)), rng.normal(0, 0.5, (len(terms), 4)))
    texts = [" ".join(rng.choice(words, rng.integers(0, 9))) for _ in range(60)] + [None, "", "unknown"]
    for r in toxicity.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), fm).collect():
        found = sorted({terms.index(t) for w in (texts[r.doc_id] or "").split() for t in toxicity.word_terms(w) if t in terms})
        z = -0.3 + sum(fm.w[i] for i in found) + sum(float(fm.v[i] @ fm.v[j]) for i in found for j in found if i < j)
        assert abs(r.score - 1 / (1 + math.exp(-z))) < 1e-9


def test_copies_that_disagree_count_once_as_toxic(spark):
    docs = [(i, "zbad one two") for i in range(40)] + [(100 + i, f"c{i} clean text {i % 7}") for i in range(200)]
    labels = [(i, None, int(i == 13)) for i in range(40)] + [(100 + i, None, int(i % 50 == 0)) for i in range(200)]
    runs = [toxicity.fit(spark.createDataFrame(docs, "doc_id long, text string").repartition(k), spark.createDataFrame(labels, "doc_id long, quality int, toxic int").repartition(7 - k)) for k in (1, 5)]
    assert runs[0].at == runs[1].at and runs[0].bias == runs[1].bias and np.array_equal(runs[0].w, runs[1].w) and np.array_equal(runs[0].v, runs[1].v)


def test_factorization_machine_learns_pairs():
    rows = [[0], [1], [2], [0, 1], [0, 2], [1, 2], []] * 30
    labels = [int(r == [0, 1]) for r in rows]
    fm = toxicity.FactorizationMachine([7, 8, 9], *toxicity.train(rows, labels, 3, epochs=60))
    assert fm.score([0, 1]) > 0.7 > 0.4 > max(fm.score(r) for r in ([0], [1], [2], [0, 2], [1, 2], []))


def test_language(spark, none):
    rng = random.Random(9)
    roots = {"aa": ["ka", "lo", "mi"], "bb": ["sch", "ung", "ber"], "cc": ["eau", "que", "ment"]}
    word = lambda k: "".join(rng.choice(roots[k]) for _ in range(3))
    rows = [(i, " ".join(word(k) for _ in range(rng.choice([6, 40, 900]))), k) for i, k in enumerate(list(roots) * 60)]
    rows += [(900, None, "aa"), (901, "", "bb"), (902, "123 ... \n", None), (None, rows[0][1], "aa"), (903, rows[0][1], None), rows[5]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({"score": F.lit(5), "margin": F.lit("clash")})
    model = lang_id.fit(docs)
    assert sorted(k for k, _ in model) == sorted(roots) and max(len(c) for _, c in model) <= lang_id.DICT_BYTES
    out = lang_id.predict(docs, model).withColumn("held_out", lang_id.held_out()).collect()
    truth = {i: k for i, _, k in rows if k}
    held = [r for r in out if r.held_out and r.doc_id < 900]
    assert held and sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    odd = {r.doc_id: r for r in out if r.doc_id in (900, 901, 902)}
    assert all(r.lang_pred == "und" and r.score == 0 and r.rejected for r in odd.values()) and len(out) == len(rows)
    kept = lang_id.accepted(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(not r.rejected for r in out)
    assert lang_id.fit(none) == [] and got(lang_id.predict(none, model)) == []
    assert {r.lang_pred for r in lang_id.predict(docs, []).collect()} == {"und"}


def test_language_is_the_smallest_output_and_needs_a_margin(spark):
    rng = random.Random(8)
    vocabulary = {k: ["".join(rng.choice(a) for _ in range(rng.randint(2, 9))) for _ in range(150)] for k, a in (("aa", "abcdei"), ("bb", "mnopeu"), ("cc", "rstiuv"))}
    speak = lambda k, n: " ".join(rng.choice(vocabulary[k]) for _ in range(n))
    learned = [(i, speak("aa" if i % 2 else "bb", rng.randint(30, 300)), "aa" if i % 2 else "bb") for i in range(500)]
    learned += [(1000 + i, learned[1][1], "aa") for i in range(400)]  # a group of copies takes one place
    model = lang_id.fit(spark.createDataFrame(learned, "doc_id long, text string, lang string"), sample_rows=100)
    assert lang_id.MIN_MARGIN < model.min_margin < 0.2 and all(len(d) > 20_000 for _, d in model)
    clean = [speak(k, 120) for k in ("aa", "bb") for _ in range(60)]
    odd = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz  ") for _ in range(1500)) for _ in range(60)] + [speak("cc", 150) for _ in range(60)]
    digits = ["½ ² ①", "١٢٣", "Ⅷ ⅓"]
    rows = [(i, t) for i, t in enumerate(clean + odd + digits)]
    got_ = {r.doc_id: r for r in lang_id.predict(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert not any(got_[i].rejected for i in range(120)) and sum(got_[i].rejected for i in range(120, 240)) >= 100
    assert all(got_[240 + i].lang_pred == "und" and got_[240 + i].score == 0 for i in range(3))
    # The choice again, by hand.
    import zstandard
    for i, t in rows[:200]:
        raw = re.sub(r"[^a-zA-Z]+", " ", t.lower()).strip().encode()
        sizes = []
        for k, d in model:
            z = zstandard.ZstdCompressor(level=lang_id.LEVEL, dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False, write_checksum=False, write_dict_id=False)
            sizes.append((sum(len(z.compress(raw[x:x + lang_id.BLOCK])) for x in range(0, len(raw), lang_id.BLOCK)), k))
        assert got_[i].lang_pred == min(sizes, key=lambda x: x[0])[1] and abs(got_[i].margin - (1 - min(sizes)[0] / max(sizes)[0])) < 1e-12


def test_language_learns_from_every_whole_text(spark):
    rng = random.Random(12)
    vocabulary = {k: ["".join(rng.choice(a) for _ in range(rng.randint(6, 12))) for _ in range(120)] for k, a in (("aa", "abcdefghij"), ("bb", "klmnopqrst"), ("both", "uvwxyz"))}
    speak = lambda k, n: " ".join(rng.choice(vocabulary[k]) for _ in range(n))
    # What tells the two apart stands behind thousands of letters; "bb" has more texts than any sample of hundreds.
    rows = [(i, speak("both", 600) + "\n" + speak("aa", 120), "aa") for i in range(30)]
    rows += [(1000 + i, f"{speak('bb', rng.randint(15, 60))} {'xy' if i % 2 else ''}", "bb") for i in range(900)]
    rows += [(3000 + i, rows[200][1], "bb") for i in range(50)] + [(4000, "語" * 30, "bb")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = lang_id.fit(docs.repartition(5))
    assert all(word.encode() in dict(model)["aa"].split(b" ") for word in vocabulary["aa"])
    new = spark.createDataFrame([(i, speak("aa" if i % 2 else "bb", 60)) for i in range(60)], "doc_id long, text string")
    assert all(r.lang_pred == ("aa" if r.doc_id % 2 else "bb") for r in lang_id.predict(new, model).collect())
    texts = {(lang, lang_id.letters(text)) for i, text, lang in rows if zlib.crc32(str(i).encode()) % 3 != 1}
    half = {(r.lang, r.raw.encode()): r.half for r in spark.createDataFrame([(k, t.decode()) for k, t in texts], "lang string, raw string").select("lang", "raw", (F.xxhash64("raw") % 2 != 0).alias("half")).collect()}

    def content(lang, of):
        words = Counter(w for k, t in of if k == lang for w in lang_id._words(t.decode()))
        common = {w for w, _ in sorted(Counter(w for k, t in texts if k == lang for w in lang_id._words(t.decode())).items(), key=lambda x: (-x[1], x[0].encode()))[:lang_id.PAIR_WORDS]}
        counts = words + Counter(f"{a} {b}" for k, t in of if k == lang for w in [lang_id._words(t.decode())] for a, b in zip(w, w[1:], strict=False) if a in common and b in common)
        out, size = [], 0
        for u, n in sorted(((u.encode(), n) for u, n in counts.items()), key=lambda x: (-x[1] * len(x[0]), x[0])):
            if (size := size + len(u) + 1) > lang_id.DICT_BYTES:
                break
            out.insert(0, u)
        return b" ".join(out)

    assert model == [(k, content(k, texts)) for k in ("bb", "aa")]
    margins = []
    for side in (False, True):
        judge = lang_id.Compressors([(k, content(k, [t for t in texts if half[t] != side])) for k in ("bb", "aa")]).classify
        margins += [m for k, t in texts if half[k, t] == side for best, _, m in [judge(t.decode())] if best == k]
    at = int(sorted(margins)[int(lang_id.MARGIN_QUANTILE * len(margins))] * lang_id.STEPS) / lang_id.STEPS
    assert model.min_margin == max(lang_id.MIN_MARGIN, lang_id.MARGIN_SHARE * at) > lang_id.MIN_MARGIN


# ---------------------------------------------------------------- 5

def jaccard_brute(rows, percent=85):
    sets = {}
    for i, t in rows:
        w = SPACE.findall(lower(t))
        sets[(i, t)] = {tuple(w[k:k + 4]) for k in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set())
    up = {k: k for k in sets}

    def find(k):
        while up[k] != k:
            k = up[k]
        return k

    keys = [k for k in sets if k[0] is not None]
    for a in keys:
        for b in keys:
            x, y = sets[a], sets[b]
            if a < b and x and y and 100 * len(x & y) >= percent * len(x | y):
                up[find(a)] = find(b)
    least = {}
    for k in keys:
        least[find(k)] = min(least.get(find(k), k[0]), k[0])
    return sorted(((i, len(sets[(i, t)]), least[find((i, t))] if i is not None else None) for i, t in rows), key=repr)


@pytest.mark.parametrize("cap", [800, 3])
def test_jaccard_join(rows, docs, cap, monkeypatch):
    monkeypatch.setattr(jaccard_join, "CAP", cap)
    want = jaccard_brute(rows)
    assert len({w[2] for w in want}) < len({w[0] for w in want})
    out = jaccard_join.near_duplicates(docs, 85, cap).select(
        F.when(F.col("did") != -(2 ** 63), F.col("did")).alias("doc_id"), "n", "component")
    assert got(out) == want


def test_one_id_with_two_texts_keeps_the_links_of_both(spark):
    rng = random.Random(9)
    w, x = prose(rng, 80, 5000), prose(rng, 80, 5000)
    rows = [(5, w), (5, x), (6, w + " end"), (8, x + " end"), (9, prose(rng, 80, 5000)), (None, w), (None, None), (5, w), (3, x.upper())]
    got_ = {(r.doc_id, r.n_shingles): r.component_id for r in jaccard_join.report(table(spark, rows)).collect()}
    assert {c for (i, _), c in got_.items() if i in (3, 5, 6, 8)} == {3} and got_[9, 77] == 9
    kept = jaccard_join.representatives(table(spark, rows)).collect()
    assert sorted((r.doc_id or 0) for r in kept) == [0, 0, 3, 9]


def test_jaccard_join_whatever_the_white_space(spark):
    """Near copies, their words apart by other runs of white space throughout."""
    rng = random.Random(13)
    rows = []
    for i in range(12):
        w = prose(rng, 100, 5000).split()
        for k, gap in enumerate((" ", "  ", "\r\n", "\n\n\t  ")):
            v = list(w)
            v[10 + 20 * k] = f"x{k}"
            rows.append((10 * i + k, gap.join(v)))
        rows.append((10 * i + 5, "".join(x + rng.choice([" ", "\n    ", "\t", " \x0b "]) for x in w)))
    want = jaccard_brute(rows)
    assert len({w[2] for w in want}) == 12
    assert got(jaccard_join.near_duplicates(table(spark, rows)).select("did", "n", "component")) == want
    sets = [(h.tolist(), keys.tolist()) for h, keys in jaccard_join.shingle_sets([b"a bb ccc dddd e", b" a\r\nbb   ccc\n\ndddd\te ", b"a b", b"a \n b"])]
    assert sets[0] == sets[1] and sets[2] == sets[3]


def test_region_join_is_exact():
    rng = np.random.default_rng(1)
    for trial in range(40):
        base = rng.choice(10_000, 60, replace=False)
        sets = []
        for _ in range(int(rng.integers(2, 40))):
            keep = base[rng.random(60) > rng.choice([0.02, 0.08, 0.5])]
            sets.append(np.unique(np.concatenate([keep, rng.choice(10_000, int(rng.integers(0, 6)))])).astype(np.uint64))
        region = jaccard_join.Region(sets, 85)
        links = region.join()
        want = components_of(len(sets), [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 85 * len(np.union1d(sets[i], sets[j]))])
        assert components_of(len(sets), links) == want and len(links) == len(sets) - len(set(want)), trial


def components_of(n, links):
    up = list(range(n))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    return [find(i) for i in range(n)]


def test_components(spark):
    rng = random.Random(8)
    links = [(i, i + 1) for i in range(40)] + [(100, 100)] + [(200, 201 + i) for i in range(30)] + [(rng.randrange(300, 360), rng.randrange(300, 360)) for _ in range(40)]
    out = dict(got(components.components(spark.createDataFrame(links, "a long, b long"))))
    want = components_of(400, links)
    assert out == {n: want[n] for n in {x for l in links if l[0] != l[1] for x in l}}
    assert got(components.components(spark.createDataFrame([], "a long, b long"))) == []


def test_jaccard_of_an_empty_table(none):
    assert got(jaccard_join.report(none)) == []


# ---------------------------------------------------------------- 6

def contamination_brute(rows, items):
    words = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for i, t in items:
        w = words.findall(lower(t))
        size = min(13, len(w))
        for a in range(len(w) - size + 1) if w else []:
            windows[tuple(w[a:a + size])].add(i)
    out = []
    for i, t in rows:
        w = words.findall(lower(t))
        hit, found = set(), set()
        for size in {len(k) for k in windows}:
            for a in range(len(w) - size + 1):
                if (at := windows.get(tuple(w[a:a + size]))):
                    hit.update(range(a, a + size))
                    found |= at
        names = sorted(str(x) for x in found if x is not None)
        out.append((i, len(w), len(hit), len(names), sha(",".join(names)), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [1 << 20, 600])
def test_decontamination(spark, rows, docs, none, block, monkeypatch):
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 4000)
    rng = random.Random(6)
    texts = [t for _, t in rows if t]
    items = [(10, " ".join(texts[3].split()[5:30])), (9, " ".join(texts[5].split()[:13]).upper()), (8, prose(rng, 30)), (7, None), (6, ""), (5, "W1"), (4, "w1 w2 nothere"),
             (3, "a b c"), (None, " ".join(texts[8].split()[2:20])), (9, " ".join(texts[9].split()[:13])), (2, "..."), (1, "é ß")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("did", F.lit(1))
    want = contamination_brute(rows, items)
    found = decontaminate.contamination(docs, bench, block_bytes=block)
    out = found.select(F.when(F.col("did") != -(2 ** 63), F.col("did")), "n_words", "n_hit", F.size("items").cast("long"),
                       F.sha2(F.concat_ws(",", "items").cast("binary"), 256), decontaminate.is_contaminated())
    assert got(out) == want
    assert sum(w[5] for w in want) >= 3
    if block > 1000:
        clean = decontaminate.clean_documents(docs, bench)
        assert clean.columns == docs.columns and clean.count() == sum(not w[5] for w in want)
        assert got(decontaminate.report(none, bench)) == []
        assert {r.n_hit for r in decontaminate.report(docs, bench.where("false")).collect()} == {0}


def test_longest_match_goes_beyond_the_window(spark):
    text = " ".join(f"t{i}" for i in range(100))
    docs = spark.createDataFrame([(1, text), (2, "t5 t6")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "zz " + " ".join(f"t{i}" for i in range(20, 60)) + " yy")], "item_id long, text string")
    assert got(decontaminate.contamination(docs, bench).select("did", "n_hit", "longest")) == [(1, 40, 40), (2, 0, 0)]


# ---------------------------------------------------------------- 7

def test_licences(spark, none):
    files = [("a/LICENSE", 1, "MIT License\nReleased under the MIT License."), ("a/x.txt", 2, "some prose here"), ("a/b/c/y.txt", 3, "prose " * 50),
             ("a/b/z.txt", 4, "code\n" * 30 + "# Licensed under the Apache License, Version 2.0"), ("q/w.txt", 5, "no licence at all"), ("a/b/COPYING", 6, "All rights reserved!"),
             (None, 7, "Released under the MIT License."), ("q/n.txt", 8, None), ("q/e.txt", 9, ""), ("a/x.txt", 2, "some prose here"), ("top", 10, "prose"),
             ("a/LICENSE2", 11, "All rights reserved."), ("q/mit", 12, "this is licensed, work under the public version of all")]
    df = spark.createDataFrame(files, "path string, doc_id long, text string").withColumns({c: F.lit("clash") for c in ("dir", "license", "score")})
    out = {(r.path, r.doc_id): (r.license, r.origin, r.from_dir) for r in licenses.scan(df).collect()}
    assert licenses.scan(df).count() == len(files)
    assert out[("a/LICENSE", 1)] == ("MIT", "own", None)
    assert out[("a/x.txt", 2)] == ("MIT", "inherited", "a")
    assert out[("a/b/c/y.txt", 3)] == ("Proprietary", "inherited", "a/b")
    assert out[("a/b/z.txt", 4)] == ("Apache-2.0", "own", None)
    assert out[(None, 7)][:2] == ("MIT", "own") or out[(None, 7)] == (None, None, None)
    assert all(out[k] == (None, None, None) for k in [("q/w.txt", 5), ("q/n.txt", 8), ("q/e.txt", 9), ("top", 10), ("q/mit", 12)])
    assert got(licenses.scan(licenses.document_files(none))) == []


def test_licence_headers_and_texts(spark):
    from nimbus.llm import license_texts as T
    text = lambda k, where: next(x for n, x in where if n == k)
    rng = random.Random(21)

    def wrapped(x, mark, width):
        w = x.split()
        return "\n".join(mark + " ".join(w[i:i + width]) for i in range(0, len(w), width))

    said = {
        "MIT License": "MIT", "The MIT License (MIT)": "MIT", "GNU GENERAL PUBLIC LICENSE": "GPL", "Apache License": "Apache",
        "Copyright (c) 2020 Foo Inc. All rights reserved.": "Proprietary", "This project is released under the MIT License.": "MIT",
        "// SPDX-License-Identifier: MIT": "MIT", "# SPDX-License-Identifier: GPL-3.0-or-later": "GPL-3.0", "# SPDX-License-Identifier: BSD-3-Clause": "BSD-3-Clause",
        "# This work is licensed under the\n# GNU General Public License,\n# version 3.": "GPL-3.0",
        "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0",
        f"MIT License\n\nCopyright (c) 2020 Foo\n\n{wrapped(text('MIT', T.TEXTS), '', 11)}": "MIT",
        f"Copyright (c) 2020, Foo\nAll rights reserved.\n\n{wrapped(text('BSD-3-Clause', T.TEXTS), ' ', 12)}": "BSD-3-Clause",
        f"Copyright (c) 2020, Foo\nAll rights reserved.\n\n{wrapped(text('BSD-2-Clause', T.TEXTS), ' ', 12)}": "BSD-2-Clause",
        f"#!/bin/sh\n{wrapped(text('Apache-2.0', T.TEXTS), '# ', 9)}\n{prose(rng, 900)}": "Apache-2.0",
        f"/*\n{wrapped(text('GPL-3.0', T.TEXTS), ' * ', 10)}\n */\n{prose(rng, 300)}": "GPL-3.0",
        f"/*\n{wrapped(text('LGPL-3.0', T.TEXTS), ' * ', 10)}\n */\n{prose(rng, 300)}": "LGPL-3.0",
        "the library of the city is licensed to sell software and to all its rights": None, "This thing is released under the Foo License.": None,
        "Er kam\nMit.\nund ging": None, "SPDX-License-Identifier: BSD-4-Clause": None,
    }
    files = [(f"d{i}/f", i, x) for i, x in enumerate(said)]
    # A whole licence file: its text goes on far beyond the opening.
    full = f"GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007\n\nPreamble\n\n{wrapped(text('GPL-3.0', T.OPENINGS), '  ', 12)}\n{prose(rng, 5000)}"
    files += [("w/COPYING", 900, full), ("w/src/a.c", 901, "int main"), ("d0/x/y", 902, "prose"), ("d14/y", 903, "prose")]
    df = spark.createDataFrame(files, "path string, doc_id long, text string")
    out = {r.doc_id: (r.license, r.origin, r.from_dir) for r in licenses.scan(df).collect()}
    assert [out[i][0] for i in range(len(said))] == list(said.values())
    assert [out[i] for i in (900, 901, 902, 903)] == [("GPL-3.0", "own", None), ("GPL-3.0", "inherited", "w"), ("MIT", "inherited", "d0"), (None, None, None)]
    strong = licenses.few_strong_terms([x for _, _, x in T.PATTERNS])
    idf, _ = licenses.weights({str(i): x for i, (_, _, x) in enumerate(T.PATTERNS)})
    for _, _, x in T.PATTERNS:
        v = {t: (c * idf[t]) ** 2 for t, c in Counter(licenses.terms(x)).items()}
        assert sum(w for t, w in v.items() if t not in strong) < licenses.THRESHOLD ** 2 * sum(v.values())


def test_strong_terms_bound_the_cosine():
    idf, _ = licenses.weights(licenses.TEMPLATES)
    strong = licenses.strong_terms(licenses.TEMPLATES)
    for text in licenses.TEMPLATES.values():
        v = {t: c * idf[t] for t, c in Counter(licenses.terms(text)).items()}
        weak = sum(w * w for t, w in v.items() if t not in strong)
        assert (weak / sum(w * w for w in v.values())) ** 0.5 < licenses.THRESHOLD


# ---------------------------------------------------------------- 10

def exact_brute(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = defaultdict(list)
    for i, t in rows:
        groups[norm(t)].append(i)
    return groups, norm


@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup(spark, rows, docs, weak, monkeypatch):
    """``weak``: a digest with few values, so that only the texts tell groups apart."""
    monkeypatch.setattr(exact_dedup, "LOCAL_BYTES", 2000)
    groups, norm = exact_brute(rows)
    least = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    if weak:
        digest = lambda c: F.pmod(F.length(c), F.lit(2)).cast("string")
        out = exact_dedup.exact_groups(docs, digest).collect()
        assert len(out) == len(rows) and len({r.keep_uid for r in out}) == len(groups)
        kept = exact_dedup.kept_documents(docs, digest)
    else:
        out = exact_dedup.report(docs).collect()
        want = sorted(((i, least[norm(t)], len(groups[norm(t)]), sha(norm(t))) for i, t in rows), key=repr)
        assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in out), key=repr) == want
        assert sum(r.kept for r in out) == len(groups) and all(r.doc_id == r.keep_id for r in out if r.kept)
        kept = exact_dedup.kept_documents(docs)
    assert kept.columns == docs.columns and {r.asDict()["__did"] for r in kept.select("__did").collect()} == {"clash"}
    assert Counter(norm(r.text) for r in kept.collect()) == Counter(list(groups))


def test_exact_dedup_of_an_empty_table(none):
    assert got(exact_dedup.report(none)) == [] and got(exact_dedup.kept_documents(none)) == []


# ---------------------------------------------------------------- queries and pipeline

@pytest.mark.skipif(not Path(SF).exists(), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    assert got(QUERIES[name](spark, SF).select(names)) == sorted(want.fetchall(), key=repr)


def test_pipeline(spark, rows, tmp_path):
    import corpus_pipeline as C
    assert [n for n, _ in C.STAGES] == ["language", "exact_dedup", "jaccard_join", "decontamination", "bpe"]
    docs = table(spark, [(i, t) for i, t in rows], extra=["score", "uid", "kept"])
    items = [(1, " ".join(next(t for _, t in rows if t and t.startswith("only")).split()[20:50]))]
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left, now = [(i, t) for i, t in rows], spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in C.STAGES:
        out = stage(spark, now, str(tmp_path))
        if name == "language":
            assert out.columns == now.columns
            texts = [t for _, t in left if t and any(c.isalpha() for c in t)]
            assert Counter(r.text for r in out.collect()) == Counter(texts)   # one language: all with letters stay
        elif name == "exact_dedup":
            groups, norm = exact_brute([(r.doc_id, r.text) for r in now.collect()])
            assert Counter(norm(r.text) for r in out.collect()) == Counter(list(groups))
        elif name == "jaccard_join":
            want = jaccard_brute([(r.doc_id, r.text) for r in now.collect()])
            assert sorted(-1 if r.doc_id is None else r.doc_id for r in out.collect()) == sorted(w[0] if w[0] is not None else -1 for w in want if w[0] is None or w[0] == w[2])
        elif name == "decontamination":
            want = contamination_brute([(r.doc_id, r.text) for r in now.collect()], items)
            assert sorted(-1 if r.doc_id is None else r.doc_id for r in out.collect()) == sorted(w[0] if w[0] is not None else -1 for w in want if not w[5])
        else:
            assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() == now.count()
        now = out
    assert got(C.run(spark, str(tmp_path))) == got(now)
    assert json.dumps(C.ORACLE_SQL) == "null"
