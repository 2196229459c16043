"""Operator 3: toxicity by a factorization machine over hashed terms.

A text's terms are its words and the first letters of its words (4, 5 and 6),
hashed to 32 bits. The machine scores

    b + sum_i w_i + sum_{i<j} <v_i, v_j>

over the terms present, so that a pair of terms (an insult, a mention of a
group) can weigh more than both alone. Terms enter only if the labelled rows
show that toxic texts hold them beyond chance; without this, thousands of
chance weights would add up in a long text. The evidence of ``pos`` toxic rows
among ``n`` is ``n KL(pos/n, p)`` (the Chernoff bound of the binomial tail) and
has to exceed the logarithm of the number of terms looked at, so that about
one enters by chance, however many rows there are. Words also enter in pairs:
two words whose common rows are toxic beyond the larger of the rates of both
alone, by the same evidence over all pairs, even if each alone is neutral.

Fitting uses at most ``SAMPLE_ROWS`` labelled rows (smallest hash of
``doc_id``) and ``MAX_TERMS`` terms; copies count once, as toxic if one of them
is.

Defined results: null and empty texts have no terms and score as such (the
machine's constant, near 0); rows without a usable label are only scored; a
table without labels gives a score of 0 throughout; repeated label rows count
once; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbus.llm.bpe import Memo
from nimbus.llm.common import prepare, staged
from nimbus.llm.lang_id import held_out

SAMPLE_ROWS = 20_000
MAX_TERMS = 20_000
MIN_ROWS = 5
FACTORS = 4
THRESHOLD = 0.7
_words = re.compile(r"[^\W\d_]+").findall


def word_terms(word: str) -> list[int]:
    """Hashed terms of a word: itself and its first letters."""
    return [zlib.crc32(f"w:{word}".encode())] + [zlib.crc32(f"{n}:{word[:n]}".encode()) for n in (4, 5, 6) if len(word) >= n]


def text_words(text: str | None) -> set[str]:
    return set(_words(text.lower())) if text else set()


def _terms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memo = Memo(word_terms)
    for b in batches:
        found = [text_words(x) for x in b.column(1).to_pylist()]
        rows = [sorted({t for w in ws for t in memo[w]}) for ws in found]
        words = [sorted({memo[w][0] for w in ws}) for ws in found]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.list_(pa.int64())), pa.array(words, pa.list_(pa.int64()))], ["toxic", "terms", "words"])


class FactorizationMachine:
    def __init__(self, terms: list[int], bias: float, w: np.ndarray, v: np.ndarray):
        self.at = {t: i for i, t in enumerate(terms)}
        self.bias, self.w, self.v = bias, w, v

    def margin(self, found: list[int]) -> float:
        v = self.v[found]
        return float(self.bias + self.w[found].sum() + 0.5 * (v.sum(0) ** 2 - (v ** 2).sum(0)).sum())

    def score(self, found: list[int]) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.margin(found), -30, 30))))


def train(rows: list[list[int]], labels: list[int], n_terms: int, epochs: int = 60, rate: float = 0.05,
          decay: float = 1e-5, factors: int = FACTORS, seed: int = 7) -> tuple[float, np.ndarray, np.ndarray]:
    """Adam on the logistic loss; rows are lists of term numbers."""
    rng = np.random.default_rng(seed)
    y = np.asarray(labels, np.float64)
    theta = [np.array([-2.0]), np.zeros(n_terms), rng.normal(0, 0.05, (n_terms, factors))]
    m, s = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
    # Rows in which nothing is found all teach the same: they are one row of their number.
    empty = np.array([not r for r in rows])
    full = np.flatnonzero(~empty)
    flat = np.concatenate([np.asarray(rows[i], np.int64) for i in full]) if len(full) else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(full)), [len(rows[i]) for i in full])
    n0, pos0 = int(empty.sum()), float(y[empty].sum())
    for step in range(1, epochs * 10 + 1):
        bias, w, v = theta
        total = np.zeros((len(full), factors))
        np.add.at(total, owner, v[flat])
        square = np.bincount(owner, (v[flat] ** 2).sum(1), len(full))
        z = bias[0] + np.bincount(owner, w[flat], len(full)) + 0.5 * ((total ** 2).sum(1) - square)
        err = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[full]
        p0 = 1 / (1 + np.exp(-bias[0]))
        n = max(1, len(y))
        g_v = np.zeros_like(v)
        np.add.at(g_v, flat, err[owner, None] * (total[owner] - v[flat]))
        grads = [np.array([(err.sum() + n0 * p0 - pos0) / n]), np.bincount(flat, err[owner], n_terms) / n + decay * w, g_v / n + decay * v]
        for k, g in enumerate(grads):
            m[k] = 0.9 * m[k] + 0.1 * g
            s[k] = 0.999 * s[k] + 0.001 * g * g
            theta[k] = theta[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-8)
    return float(theta[0][0]), theta[1], theta[2]


def pairs(rows: list[list[int]], labels: list[int], vocabulary: list[int], p: float) -> list[int]:
    """Places in ``vocabulary`` of the words of pairs that are toxic beyond the
    rates of both words and ``p``, the pair with most evidence first."""
    at = {t: i for i, t in enumerate(vocabulary)}
    n_terms, y = len(vocabulary), np.asarray(labels, np.int64)
    if n_terms < 2:
        return []
    rows = [np.sort(np.array([at[t] for t in r], np.int64)) for r in rows]
    holders: list[list[int]] = [[] for _ in vocabulary]
    for k, r in enumerate(rows):
        for i in r.tolist():
            holders[i].append(k)
    rate = np.array([max(p, y[h].mean()) if h else 1.0 for h in holders])
    least = math.log(n_terms * (n_terms - 1) / 2)
    found: list[tuple[float, int, int]] = []
    for i, held in enumerate(holders):
        toxic = [rows[k] for k in held if y[k]]
        # Toxic rows by themselves tell which partners have enough evidence at best.
        if rate[i] >= 1 or len(toxic) * -math.log(rate[i]) < least:
            continue
        pos = np.bincount(np.concatenate(toxic), minlength=n_terms)
        base = np.maximum(rate, rate[i])
        able = np.flatnonzero((np.arange(n_terms) > i) & (pos * -np.log(base) >= least))
        if not len(able):
            continue
        n = np.bincount(np.concatenate([rows[k] for k in held]), minlength=n_terms)[able]
        q, b = pos[able] / n, base[able]
        with np.errstate(divide="ignore", invalid="ignore"):
            kl = q * np.log(q / b) + np.where(q < 1, (1 - q) * np.log((1 - q) / (1 - b)), 0)
        ok = np.flatnonzero((q > b) & (n >= MIN_ROWS) & (n * kl >= least))
        found += [(-float(n[k] * kl[k]), i, int(able[k])) for k in ok]
    return list(dict.fromkeys(x for _, i, j in sorted(found) for x in (i, j)))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, max_terms: int = MAX_TERMS,
        min_z: float | None = None) -> FactorizationMachine:
    """Learn from the labelled rows that are not held out. ``min_z``: a fixed
    bound of the terms' z scores in place of the evidence."""
    spark = docs.sparkSession
    prepare(spark)
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    # A bounded number of ids: the documents are not shuffled to find theirs.
    chosen = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("toxic", "text")
    # Texts with the same terms (copies above all) count once.
    different = texts.mapInArrow(_terms_of, "toxic int, terms array<long>, words array<long>").groupBy("terms", "words").agg(F.max("toxic").alias("toxic"))
    rows = staged(different.select("toxic", "terms", "words"), "toxic-terms")
    n, pos = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    p = pos / n if n else 0.0
    if not 0 < p < 1:
        return FactorizationMachine([], -30.0 if p < 1 else 30.0, np.zeros(0), np.zeros((0, FACTORS)))
    counted = rows.select(F.explode("terms").alias("term"), "toxic").groupBy("term").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("pos"))
    counted = staged(counted.where(F.col("n") >= MIN_ROWS), "toxic-counts")
    if min_z is None:
        q = F.col("pos") / F.col("n")
        kl = F.when(q < 1, q * F.log(q / p) + (1 - q) * F.log((1 - q) / (1 - p))).otherwise(-math.log(p))
        value, least = F.when(q > p, F.col("n") * kl), math.log(max(2, counted.count()))
    else:
        value, least = (F.col("pos") - F.col("n") * p) / F.sqrt(F.col("n") * p * (1 - p)), min_z
    kept = counted.withColumn("z", value).where(F.col("z") >= least).orderBy(F.desc("z"), "term").limit(max_terms).select("term")
    found = [r["term"] for r in kept.collect()]
    # At most max_terms words, the most frequent ones, and sample_rows rows.
    vocabulary = [r["term"] for r in counted.join(rows.select(F.explode("words").alias("term")).distinct(), "term", "left_semi").orderBy(F.desc("n"), "term").limit(max_terms).collect()]
    of = sorted(_only(rows, vocabulary, "words").collect())
    paired = [vocabulary[i] for i in pairs([r["terms"] for r in of], [r["toxic"] for r in of], vocabulary, p)]
    terms = sorted(list(dict.fromkeys(found + paired))[:max_terms])
    at = {t: i for i, t in enumerate(terms)}
    got = sorted((r["toxic"], sorted(at[t] for t in r["terms"])) for r in _only(rows, terms).collect())
    bias, w, v = train([r for _, r in got], [y for y, _ in got], len(terms))
    return FactorizationMachine(terms, bias, w, v)


def _only(rows: DataFrame, terms: list[int], of: str = "terms") -> DataFrame:
    """``toxic, terms`` with the chosen terms of column ``of`` only (at most ``max_terms``)."""
    shared = rows.sparkSession.sparkContext.broadcast(set(terms))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [[t for t in r if t in shared.value] for r in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keep, pa.list_(pa.int64()))], ["toxic", "terms"])

    return rows.select("toxic", of).mapInArrow(run, "toxic int, terms array<long>")


def score(docs: DataFrame, model: FactorizationMachine) -> DataFrame:
    """``doc_id, score`` for every whole text."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)  # at most max_terms terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fm = shared.value
        memo = Memo(lambda word: [fm.at[t] for t in word_terms(word) if t in fm.at])
        nothing = fm.score([])
        for b in batches:
            scores = []
            for text in b.column(1).to_pylist():
                found = {i for w in text_words(text) if (hit := memo[w]) for i in hit}
                scores.append(fm.score(sorted(found)) if found else nothing)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def predictions(scored: DataFrame) -> DataFrame:
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
